"""The training-data operators on small and awkward tables, against brute force."""

import gzip
import hashlib
import itertools
import zlib
from collections import Counter
from math import log10

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF001
from farsight import llm
from farsight.llm import decontam, linededup, mixing, neardup, ppm, quality, shingles, simhash, tokens, urlfilter, util, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, key string, k long, _md5 string"


def docs_df(spark, rows):
    """rows: (doc_id, text, source); the other columns clash with names used inside."""
    return spark.createDataFrame([(i, t, None, s, None, "x", None, 1, "y") for i, t, s in rows], DOCS)


def prose(seed, n):
    g = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in g.integers(0, 5000, n))


@pytest.fixture(scope="module")
def awkward(spark):
    long = prose(1, 20000)
    base = prose(2, 300)
    near = base.split()
    near[7] = "changed"
    rows = [(1, None, "a"), (2, "", None), (None, "tie tie", "b"), (3, base, "a"), (4, " ".join(near), "a"), (5, base, None),
            (6, long, "c"), (6, long, "c"), (6, prose(3, 80), "c"), (40, "one two", "b"), (41, "\n \t\n", "b"), (42, "Éa ß 漢字 " * 30, "d")]
    return docs_df(spark, rows).cache()


def empty(spark):
    return docs_df(spark, [])


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = llm.QUERIES[name](spark, SF001)
    rel = con.sql(llm.SQL[name])
    order = sorted(got.columns)
    assert order == sorted(rel.columns)
    key = lambda cols, rows: sorted((tuple(r[cols.index(c)] for c in order) for r in rows), key=repr)
    assert key(got.columns, [tuple(r) for r in got.collect()]) == key(rel.columns, rel.fetchall())


def test_registered():
    names = E.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names


def test_mix(spark, awkward):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    size = Counter()
    for r in rows:
        size[r.source] += r.size
        assert 0 <= r.taken <= 3 * r.size and (r.size or not r.taken)
    assert all(r.source_size == size[r.source] and r.target <= 3 * size[r.source] + 1e-9 for r in rows)
    targets = {r.source: r.target for r in rows}
    assert sum(targets.values()) == pytest.approx(sum(size.values()))
    for s, t in targets.items():
        assert abs(sum(r.taken for r in rows if r.source == s) - t) <= 3 * mixing.BLOCK
    assert mixing.mix(empty(spark)).count() == 0
    kept = mixing.mixed_documents(awkward)
    assert kept.columns[:len(awkward.columns)] == awkward.columns and kept.where("taken = 0").count() == 0


def test_urls(spark):
    page = "page_id long, url string, html string, host string, node string"
    link = '<html><link rel="canonical" href="{}"></html>'
    rows = [(1, "http://A.com/de/x", None, "h", "n"), (2, "https://b.net/1", link.format("http://a.com/de/x"), "", ""),
            (3, "https://c.net/2?utm_source=x#top", '<meta http-equiv="refresh" content="0; url=https://b.net/1/">', "", ""),
            (4, None, None, "", ""), (5, "no scheme", "", "", ""), (6, "https://sub.org/es/1", "", "", ""),
            (7, "https://x.example.org/es/1", "", "", ""), (7, "https://x.example.org/es/1", "", "", ""),
            (8, "https://d.net/", link.format("/q"), "", ""), (9, "http://www.d.net/q", link.format("https://sub.org/es/1"), "", "")]
    rules = spark.createDataFrame(urlfilter.RULES, "verdict string, host string, path string")
    got = {r.page_id: r for r in urlfilter.judge(spark.createDataFrame(rows, page), rules).collect()}
    assert {k: (v.verdict, v.reason) for k, v in got.items()} == {
        1: ("block", "rule"), 2: ("block", "alias"), 3: ("block", "alias"), 4: ("allow", "default"), 5: ("allow", "default"),
        6: ("allow", "rule"), 7: ("block", "rule"), 8: ("allow", "default"), 9: ("allow", "default")}
    assert got[4].host == "" and got[1].host == "a.com" and got[7].rule == "example.org/es/"
    assert urlfilter.judge(spark.createDataFrame([], page), rules).count() == 0


def test_components(spark):
    edges = [(f"{i:04d}", f"{i + 1:04d}") for i in range(200)] + [("hub", f"s{i}") for i in range(50)] + [("self", "self")]
    got = {r.node: r.label for r in util.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"{i:04d}"] for i in range(201)} == {"0000"} and {got[f"s{i}"] for i in range(50)} == {"hub"} and "self" not in got


def test_lines(spark):
    run = ["a1 " * 20, "a2 " * 20, "a3 " * 20]
    single = "s " * 55
    rows = [(1, "\n".join(["only here"] + run + [single]), "a"), (2, "\n".join(["another"] + run + ["", "tail"]), "a"),
            (3, single, "a"), (None, single + "\nend", "a"), (4, "short line", "b"), (5, "short line", "b"), (6, None, "b"), (7, "", "b")]
    got = {r.doc_id: r for r in linededup.dedup_lines(docs_df(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "another\n\ntail" and got[3].text == "" and got[None].text == "end"
    assert got[4].text == got[5].text == "short line" and got[6].text is None and got[7].text == "" and got[1].node == "x"
    assert linededup.dedup_lines(empty(spark)).count() == 0


def test_ppm(spark, awkward):
    got = ppm.scores(awkward).collect()
    assert len(got) == awkward.count()
    rows = [(r.doc_id, r.text or "") for r in awkward.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not held(i) for w in [*ppm.tokens(t), ppm.END])
    n, v = sum(count.values()), len(count)
    want = sorted((i is None, i or 0, held(i), len(ppm.tokens(t)) + 1, sum(count[w] > 0 for w in [*ppm.tokens(t), ppm.END]), n,
                   round(sum(log10((count[w] + 1) / (n + v + 1)) for w in [*ppm.tokens(t), ppm.END]), 4)) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got) and ppm.scores(empty(spark)).count() == 0


def test_ppm_trie_against_brute_force():
    words, n = [b"abab", b"ab", b"b\xc3\xa9", b"abcabc", ppm.END], np.array([3.0, 5, 1, 2, 4])
    trie = ppm.Trie(*ppm.grams(words, n))
    seen: dict[bytes, Counter] = {}
    for w, k in zip(words, n):
        seg = b" " + w + (b"" if w == ppm.END else b" ")
        for p in range(1, len(seg)):
            for d in range(min(ppm.ORDER, p) + 1):
                seen.setdefault(seg[p - d:p], Counter())[seg[p]] += k
    for w in [*words, b"zzz", b"abc", b"ababx", b"a"]:
        seg, p = b" " + w + (b"" if w == ppm.END else b" "), 1.0
        for at in range(1, len(seg)):
            barred: set[int] = set()
            for d in range(min(ppm.ORDER, at), -1, -1):
                c = {s: k for s, k in seen.get(seg[at - d:at], {}).items() if s not in barred}
                if not c:
                    continue
                whole = sum(c.values()) + len(c)
                if seg[at] in c:
                    p *= c[seg[at]] / whole
                    break
                p *= len(c) / whole
                barred |= c.keys()
            else:
                p /= 256 - len(barred)
        assert trie.log10([w])[0] == pytest.approx(log10(p))


def test_ppm_distributed_trie_equals_a_whole_one(spark, monkeypatch):
    monkeypatch.setattr(ppm, "PART_GRAMS", 100)
    monkeypatch.setattr(ppm, "CACHED_GRAMS", 50)
    g = np.random.default_rng(7)
    words = sorted({bytes(g.choice(list(b"abcd\xc3\xa9"), g.integers(1, 12)).tolist()) for _ in range(400)}) + [ppm.END]
    n = g.integers(0, 9, len(words))
    trie = ppm.Trie(*ppm.grams([w for w, k in zip(words, n) if k], n[n > 0].astype(float)))
    df = spark.createDataFrame([(bytearray(w), int(k)) for w, k in zip(words, n)], "word binary, n long").repartition(3)
    got = {bytes(r.word): (r.n, r.log) for r in ppm.coded_words(df).collect()}
    assert got == {w: (k, pytest.approx(x, abs=1e-9)) for w, k, x in zip(words, n.tolist(), trie.log10(words).tolist())}
    # without training texts all bytes are equally likely
    none = ppm.coded_words(df.selectExpr("word", "0L AS n")).collect()
    assert all(r.log == pytest.approx(-log10(256) * (len(r.word) + (bytes(r.word) != ppm.END))) for r in none)
    assert ppm.coded_words(df.limit(0)).count() == 0


def test_ppm_codes_in_six_bytes_of_context():
    trie = ppm.Trie(*ppm.grams([b"1abcdex", b"2abcdey"], np.array([10.0, 10])))
    right, wrong = trie.log10([b"1abcdex", b"1abcdey"])
    assert right > wrong + 0.5


def test_ppm_escapes_count_all_training_texts(spark, monkeypatch):
    texts = [t for t in (prose(90 + i, 12) for i in range(60)) if zlib.crc32(t.encode()) % 8][:20]
    counted, count = [], ppm.escapes
    monkeypatch.setattr(ppm, "escapes", lambda texts, corpus: counted.append(texts.count()) or count(texts, corpus))
    training = spark.createDataFrame([(t,) for t in texts], "text string")
    assert ppm.scores(docs_df(spark, [(1, texts[0], "a")]), training).count() == 1 and counted == [20]


def ppm_scores(texts, held):
    """log10 probability of each text, by counting whole words and their two predecessors."""
    laid = [[*ppm.tokens(t), ppm.END] for t in texts]
    taught = [i for i, h in enumerate(held) if not h]
    n = Counter(w for i in taught for w in laid[i])
    words = sorted({w for x in laid for w in x})
    trie = ppm.Trie(*ppm.grams(list(n), np.array(list(n.values()), float)))
    log = dict(zip(words, trie.log10(words).tolist()))
    hashed = dict(zip(words, ppm._hashes(words).tolist()))
    before = lambda x, k: (None, *x[:k])[-2:] if k < 2 else (x[k - 2], x[k - 1])
    follow: dict[tuple, Counter] = {}
    for i in taught:
        for k, w in enumerate(laid[i]):
            follow.setdefault(before(laid[i], k), Counter())[w] += 1
    upper = {}
    for c, seen in follow.items():
        kept = {w: m for w, m in seen.items() if m >= 3}
        if kept:
            top = min(kept, key=lambda w: (-kept[w], hashed[w]))
            upper[c] = top, min(3, 4 * kept[top] // sum(kept.values()))
    steps = []
    for x in laid:
        own, run, out = {}, 0, []
        for k, w in enumerate(x):
            c = before(x, k)
            guess, state = (own[c], 0) if c in own else (upper[c][0], 16 + 4 * upper[c][1]) if c in upper else (None, None)
            own[c] = w
            out.append((w, guess, None if guess is None else state + min(3, run)))
            if guess is not None:
                run = run + 1 if guess == w else 0
        steps.append(out)
    uses = Counter((s, g == w) for i in taught for w, g, s in steps[i] if g is not None)
    share = lambda s: (uses[s, True] + 0.5) / (uses[s, True] + uses[s, False] + 1)
    code = lambda w, g, s: (log[w] if g is None else log10(share(s)) if g == w
                            else log10(1 - share(s)) - log10(max(1e-9, 1 - 10 ** log[g])) + log[w])
    return [sum(code(*step) for step in x) for x in steps], len(upper)


def test_ppm_holds_every_context_of_two_words(spark, monkeypatch):
    # what tasks hold is small here, so that contexts, words and foreseen words come by joins
    for name, most in (("MAX_PHRASES", 4), ("PHRASE_CELLS", 4), ("CACHED_PHRASES", 4), ("FREQUENT", 5), ("CHUNK_BYTES", 700)):
        monkeypatch.setattr(ppm, name, most, raising=False)
    g = np.random.default_rng(5)
    lines = [" ".join(f"{chr(97 + k)}{j}" for j in g.integers(0, 40, 6)) for k in range(12)]
    texts = [" ".join(lines[j] for j in g.integers(0, 12, 4)) + f" only{i}" for i in range(60)] + ["", "zz", lines[0], lines[0]]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    want, contexts = ppm_scores(texts, held)
    assert contexts > 60 and 0 < sum(held) < len(texts)
    df = docs_df(spark, [(i, t, "a") for i, t in enumerate(texts)]).repartition(3)
    assert {r.doc_id: r.score for r in ppm.scores(df).collect()} == {i: pytest.approx(x, abs=1e-6) for i, x in enumerate(want)}
    taught = spark.createDataFrame([(t,) for t, h in zip(texts, held) if not h], "text string")
    assert ppm.phrases(taught).count() == contexts
    # one pair of words that many words follow, and one that stands in every text
    many = spark.createDataFrame([(f"x y u{i} x y z v{i}",) for i in range(50)], "text string")
    got = ppm.phrases(many).collect()
    assert sorted((r.n, r.sure) for r in got) == [(50, 3)] * 3


def test_ppm_words_are_hashed_and_counted_together(monkeypatch):
    words = [b"ab", ppm.END, b"b\xc3\xa9", b"x" * 70_000, b"\x00", ppm.END, b"ab"]
    want = [int(shingles.hashed_texts([w])[0][0][0]) if w != ppm.END else int(ppm._END_HASH[0]) for w in words]
    monkeypatch.setattr(ppm, "hashed_texts", lambda raws: pytest.fail("a word at a time"))
    assert ppm._hashes(words).view(np.uint64).tolist() == want and len(ppm._hashes([])) == 0
    texts = ["", " A b\n\nA", "\x0b\x0cÉ\xa0é\x1cz\r\t", "B\x00 b"]
    for times in (1, 0):
        got = ppm._counted(pa.array(texts), times).to_pydict()
        count = Counter(w for t in texts for w in [*ppm.tokens(t), ppm.END])
        assert dict(zip(got["word"], got["n"])) == {w: n * times for w, n in count.items()} and len(got["word"]) == len(count)
    both = ppm._summed([ppm._counted(pa.array(texts), 1), ppm._counted(pa.array(["new a"]), 0)]).to_pydict()
    assert dict(zip(both["word"], both["n"])) == {**count, b"new": 0}


def test_ppm_cells_of_a_part_are_added_at_once(monkeypatch):
    g = np.random.default_rng(1)
    cells = g.integers(0, 60, (50, 5)).astype(np.uint16)
    calls, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or count(*a, **k))
    sums = {7: np.full(64, 1, np.uint8)}
    ppm._add_cells(sums, {k: [c.tobytes() for c in cells[k::2]] for k in (0, 1)} | {7: [cells[0].tobytes()]}, 64)
    assert len(calls) == 3
    for k in (0, 1):
        assert sums[k].tolist() == np.minimum(3, count(cells[k::2].reshape(-1), minlength=64)).tolist()
    assert sums[7].tolist() == np.minimum(3, 1 + count(cells[0], minlength=64)).tolist()


def test_ppm_pairs_and_places():
    u = lambda *x: np.array(x, np.uint64)
    # different pairs may share a key
    got = ppm._counted_pairs(u(1, 2, 1, 2, 3), u(9, 8, 9, 8, 7), u(5, 5, 5, 5, 4), np.array([1, 2, 3, 4, 5]))
    assert sorted(zip(*(x.tolist() for x in got))) == [(1, 9, 4), (2, 8, 6), (3, 7, 5)]
    assert [len(x) for x in ppm._counted_pairs(u(), u(), u())] == [0, 0, 0]
    # numbers whose upper bits are equal, and some that are not
    for x in (np.array([8, 9, 8, 9, 10, 8]), np.array([1, 2, 1, -3, 2, 1]) << 40, np.zeros(0, np.int64)):
        order = ppm._equal_together(x)
        runs = [list(r) for _, r in itertools.groupby(order.tolist(), key=lambda i: x[i])]
        assert sorted(order.tolist()) == list(range(len(x))) and len(runs) == len(set(x.tolist())) and all(r == sorted(r) for r in runs)
    for keys in ([], [0], [3, 0, -5], [3, -5], list(range(-40, 0)) + list(range(1, 60)), list(range(-40, 60))):
        index = ppm.Index(np.array(keys, np.int64))
        for i in (index, ppm.Index.again(index.slots, index.place)):
            assert i.find(np.arange(-70, 70)).tolist() == [keys.index(k) if k in keys else -1 for k in range(-70, 70)]


def test_ppm_counts_pairs_beyond_a_byte(spark):
    texts = spark.createDataFrame([("a b c " * 300,), ("a b d " * 7,), ("a b c " * 300,)], "text string").repartition(2)
    hashed = dict(zip("abc", ppm._hashes([b"a", b"b", b"c"]).tolist()))
    # after b c: a each time but at the ends; after b d: a; after c a and d a: b; after a b: c or d
    assert sorted((r.word, r.n, r.sure) for r in ppm.phrases(texts).collect()) == sorted(
        [(hashed["c"], 607, 3), (hashed["a"], 598, 3), (hashed["a"], 6, 3), (hashed["b"], 598, 3), (hashed["b"], 6, 3),
         (hashed["a"], 3, 3), (hashed["b"], 3, 3)])


def test_quality(spark):
    good = [(i, prose(i, 60) + ".", "a") for i in range(200)]
    bad = [(1000 + i, " ".join(f"W{i}!!" for _ in range(60)), "a") for i in range(60)]
    odd = [(5000, None, "a"), (5001, "", "a"), (None, "x", "a"), (5002, prose(9, 20000), "a"), (5002, prose(9, 20000), "a")]
    labels = spark.createDataFrame([(i, int(i < 1000), None) for i, _, _ in good + bad] + [(5001, None, "z"), (None, 1, "z")],
                                   "doc_id long, quality int, text string")
    got = quality.quality_scores(docs_df(spark, good + bad + odd), labels).collect()
    assert len(got) == 265 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    marks = [(r.doc_id < 1000) == bool(r.predicted) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 5000]
    assert len(marks) > 30 and sum(marks) / len(marks) > 0.95
    assert {r.score for r in quality.quality_scores(docs_df(spark, odd), labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(empty(spark), labels).count() == 0


def test_near(spark, awkward):
    got = neardup.near_classes(awkward).collect()
    by = {(r.doc_id, r.text_md5): r for r in got}
    assert len(got) == awkward.count()
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    rows = {(r.doc_id, md5(r.text)) for r in awkward.collect()}
    assert set(by) == rows
    ids = {r.doc_id: r.class_id for r in got if r.doc_id not in (6, None)}
    assert ids[3] == ids[4] == ids[5] == 3 and ids[1] == ids[2] == 1 and ids[40] == 40
    left = neardup.drop_near_duplicates(awkward).collect()
    assert sorted(str(r.doc_id) for r in left) == sorted(["1", "3", "6", "6", "40", "41", "42", "None"])
    assert neardup.near_classes(empty(spark)).count() == 0


def test_near_large_group(spark):
    base = prose(5, 200).split()
    rows = [(i, " ".join(base[:i] + ["new"] + base[i + 1:]), "a") for i in range(60)] + [(100 + i, prose(100 + i, 150), "a") for i in range(40)]
    got = {r.doc_id: r.class_id for r in neardup.near_classes(docs_df(spark, rows)).collect()}
    assert {got[i] for i in range(60)} == {0} and all(got[100 + i] == 100 + i for i in range(40))


def test_near_copies_on_one_template(spark):
    """Pages 0.75 alike that hold many small groups of copies, against brute force."""
    template, rows = prose(70, 300).split(), []
    for g in range(70):
        own = [f"g{g}x{k}" for k in range(46)]
        for c in range(3):
            rows.append((len(rows), " ".join(template + own[:34] + [f"c{c}g{g}y{k}" for k in range(2 + g % 20)] + own[34:]), "a"))
    docs = docs_df(spark, rows)
    weights = neardup.cell_weights(*neardup._document_counts(docs.select("text")))
    blobs = [neardup.packed(shingles.shingles(w)) for w in shingles.word_hashes([t for _, t, _ in rows])]
    want = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if neardup.weighted_jaccard(blobs[i], blobs[j], weights) >= neardup.THRESHOLD:
                want = [want[j] if x == want[i] else x for x in want] if want[j] < want[i] else [want[i] if x == want[j] else x for x in want]
    assert 70 <= len(set(want)) < len(rows)
    got = {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_tokens(spark, awkward):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    more = docs_df(spark, [(70 + i, x, "a") for i, x in enumerate(["a  b\n\nc ", " <|endoftext|> x<|endoftext|>", "it's 12 o'clock", "　x   y"])])
    docs = awkward.unionByName(more)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False))) for r in docs.collect())
    got = tokens.token_counts(docs, path).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got) and tokens.token_counts(empty(spark), path).count() == 0


def _lines(seed, n, words):
    return [" ".join(f"x{seed}y{i}w{j}" for j in range(words)) for i in range(n)]


def test_line_runs_beyond_the_first_holder(spark):
    (one,), (two,) = _lines(1, 1, 50), _lines(2, 1, 28)
    texts = {1: one, 2: f"{one}\n{two}\nrest a", 3: f"head b\n{one}\n{two}\nrest c", 4: f"{one}\nother d", 5: f"{one}\n{two}\nrest e"}
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs_df(spark, [(i, t, "a") for i, t in texts.items()])).collect()}
    assert got == {1: one, 2: f"{two}\nrest a", 3: "head b\nrest c", 4: "other d", 5: "rest e"}


def test_line_runs_of_a_repeating_text(spark):
    long = "\n".join(["same"] * 20000)
    period = "\n".join(f"line {i % 7} of a poem" for i in range(4000))
    got = {r.doc_id: r.text.split("\n") for r in linededup.dedup_lines(docs_df(spark, [(1, long, "a"), (2, period, "b"), (3, long + "\nsame", "c")])).collect()}
    assert got[1] == ["same"] * len(got[1]) and len(got[1]) < 100 and len(got[2]) < 100 and len(got[3]) < 5


CLASH = "doc_id long, text string, source string, row string, id long, md5 string, gone string, body string, of_id long, gone_id int, `a b` string, taken long, n int"


def test_stages_keep_every_column(spark):
    rows = [(i, "\n".join(prose(100 * i + k, 40) for k in range(3)), "ab"[i % 2], f"r{i}", -i, "m", None, "b", i, 7, "c", 5, 1) for i in range(30)]
    rows += [(90, None, None, "r", 1, None, None, None, None, None, None, None, None), (None, "", "a", "r", 1, "m", "g", "b", 2, 3, "c", 4, 5)]
    docs = spark.createDataFrame(rows, CLASH)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, prose(100, 40))], "item_id long, text string")
    want = {r.row: r for r in docs.collect()}
    stages = {"quality": lambda d: quality.drop_low_quality(d, labels), "lines": linededup.dedup_lines, "near": neardup.drop_near_duplicates,
              "leaks": lambda d: decontam.drop_leaks(d, bench), "mix": mixing.mixed_documents}
    for name, stage in stages.items():
        out = stage(docs)
        got = out.collect()
        assert got and (out.columns[:len(docs.columns)] == docs.columns or name == "mix"), name
        for r in got:
            if r.row != "r":
                made = ("source_size", "target", "taken") if name == "mix" else ()
                assert all(r[c] == want[r.row][c] for c in docs.columns if c not in made), (name, r.row)
        assert stage(docs.limit(0)).count() == 0, name
    # nothing is learnt: nothing is rejected
    assert quality.drop_low_quality(docs, labels.limit(0)).count() == len(rows)
    assert quality.drop_low_quality(docs, labels.where("quality = 1")).count() == len(rows)


def test_leaks(spark):
    items = [(1, prose(50, 30)), (2, prose(51, 55)), (3, "two words"), (4, None), (1, prose(52, 8))]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    far = prose(60, 9000)
    worn = items[1][1].split()
    worn[3] = "other"
    rows = [(1, far + " " + items[0][1].upper() + ", " + far, "a"), (2, prose(61, 40) + " " + " ".join(worn) + ".", "a"), (3, "Two, words!", "a"),
            (4, " ".join(items[1][1].split()[:25]), "a"), (5, None, "a"), (6, items[4][1], "a"), (6, items[4][1], "a"), (None, items[0][1], "a")]
    got = sorted((str(r.doc_id), r.item_id) for r in decontam.leaks(docs_df(spark, rows), bench).collect())
    assert got == [("1", 1), ("2", 2), ("3", 3), ("6", 1), ("None", 1)]
    assert sorted(r.doc_id for r in decontam.drop_leaks(docs_df(spark, rows), bench).collect()) == [4, 5]
    assert decontam.leaks(empty(spark), bench).count() == 0 and decontam.leaks(docs_df(spark, rows), bench.limit(0)).count() == 0


def test_leaks_repeats_and_pieces(spark):
    repeats = prose(80, 14) + " same" * 80 + " " + prose(81, 14)
    item, parts = prose(82, 35).split(), prose(83, 300).split()
    bench = spark.createDataFrame([(1, repeats), (2, " ".join(item)), (3, " ".join(parts))], "item_id long, text string")
    rows = [(100 + k, f"{prose(200 + k, k)} {repeats} {prose(300 + k, 200)}", "a") for k in range(0, 64, 8)]
    rows += [(200 + k, f"{prose(400 + k, k)} {' '.join(item[:17])} {prose(500 + k, 10)} {' '.join(item[17:])} {prose(600 + k, 90)}", "a")
             for k in range(32)]
    rows.append((300, " ".join(x for k in range(0, 300, 60) for x in (*parts[k:k + 60], prose(700 + k, 3000))), "a"))
    rows.append((301, " ".join(parts[:240]), "a"))
    want = []
    cut = lambda t: set(zip(*(t.split()[k:] for k in range(5))))
    for i, t, _ in rows:
        for no, x in ((1, repeats), (2, " ".join(item)), (3, " ".join(parts))):
            share = len(cut(x) & cut(t)) / len(cut(x))
            if share >= decontam.THRESHOLD:
                want.append((i, no, round(share, 9)))
    assert len(want) == 41
    got = [(r.doc_id, r.item_id, round(r.containment, 9)) for r in decontam.leaks(docs_df(spark, rows), bench).collect()]
    assert sorted(got) == sorted(want)


def test_warc_round_trip_and_salvage(spark, tmp_path):
    pages = spark.createDataFrame([(3, "http://a/ b", "same"), (1, None, "same"), (2, "x", None), (None, "y", "same"), (9, "z", "WARC/1.1\r\n\r\nfake é")],
                                  "page_id long, url string, html string")
    for kind in ("none", "gzip"):
        out = str(tmp_path / kind)
        warc.write_warc(pages.coalesce(1), out, compression=kind)
        read = warc.read_warc(spark, out)
        got = {r.record_id: r for r in read.collect()}
        assert warc.gaps(read).count() == 0 and len(got) == 5
        assert {k: (r.type, r.refers_to) for k, r in got.items()} == {
            "<urn:page:3>": ("revisit", "<urn:page:1>"), "<urn:page:1>": ("response", None), "<urn:page:2>": ("response", None),
            "<urn:page:>": ("revisit", "<urn:page:1>"), "<urn:page:9>": ("response", None)}
        assert bytes(got["<urn:page:9>"].payload) == "WARC/1.1\r\n\r\nfake é".encode() and got["<urn:page:3>"].payload_bytes == 4
    (plain,) = (tmp_path / "none").glob("part-*")
    raw = plain.read_bytes()
    parts = [b"WARC/1.1\r\nWARC-Type" + p for p in raw.split(b"WARC/1.1\r\nWARC-Type")[1:]]
    broken = b"junk" + parts[0] + parts[1].replace(b"Content-Length", b"Content-Lexgth") + b"".join(parts[2:])
    found = list(warc.walk(broken))
    assert sum(n for _, n, _, _ in found) == len(broken) and sum(r is None for _, _, _, r in found) == 2 and sum(r is not None for *_, r in found) == 4
    members = [gzip.compress(p) for p in parts]
    bad = members[0] + members[1][:40] + b"\0" * 9 + members[2] + members[3][:-6]
    found = list(warc.walk_members(bad))
    # the last member lost its check sum alone: its record is whole, by its own digest
    assert [r is not None for *_, r in found] == [True, False, True, True, False]
    assert warc.read_warc(spark, str(tmp_path / "none"), payload=False).where("payload is not null").count() == 0


def test_warc_records_before_a_cut(spark, tmp_path):
    pages = spark.range(300).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "concat('page ', id, repeat(md5(cast(id as string)), 20)) AS html")
    warc.write_warc(pages.coalesce(1), str(tmp_path / "w"), compression="gzip")
    (file,) = (tmp_path / "w").glob("part-*")
    whole = file.read_bytes()
    for raw, least, most in ((whole[:-12], 299, 300), (whole[:len(whole) // 2], 100, 200),
                             (whole[:len(whole) // 2] + b"\xff" * 50 + whole[len(whole) // 2 + 50:], 100, 299)):
        found = list(warc.walk_members(raw))
        good = [r["record_id"] for *_, r in found if r]
        assert least <= len(good) <= most and good[:100] == [f"<urn:page:{i}>" for i in range(100)]
        assert found[-1][2].startswith("gzip member") and len(found) == len(good) + 1


def test_simhash(spark, awkward):
    rows = simhash.fingerprints(awkward).collect()
    data = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in awkward.collect()))
    want = []
    for i, (gone, k, t) in enumerate(data):
        cut, after = len(t) // 4, data[(i + 1) % len(data)][2]
        want.append((gone, k, len(t), hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in rows) == sorted(want)
    assert {r.fingerprint for r in rows if r.doc_id in (3, 5)}.__len__() == 1
    dist = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    for r in rows:
        assert r.near_edited == 1 - dist(r.fingerprint, r.edited_fingerprint) / 64
        if r.doc_id is not None and r.doc_id % 20 == 0:
            assert r.near_docs == sum(dist(r.fingerprint, o.fingerprint) <= simhash.RADIUS for o in rows) - 1
    assert simhash.fingerprints(empty(spark)).count() == 0


def test_permuted_tables_are_exact(spark):
    g = np.random.default_rng(1)
    fps = g.integers(-2**63, 2**63 - 1, 60, dtype=np.int64)
    near = [int(np.int64(f) ^ np.int64(sum(1 << int(b) for b in g.choice(63, k, replace=False)))) for f in fps for k in (1, 2, 3, 4)]
    every = sorted({*fps.tolist(), *near})
    df = spark.createDataFrame([(f,) for f in every], "fp long")
    got = {(r.query, r.fp) for r in simhash.search(df, df).collect()}
    assert got == {(a, b) for a in every for b in every if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}


def test_word_hashes():
    texts = ["a b  c", "", " \n", "B", "x" * 200_000 + " a " + "y " * 100_000]
    got = list(shingles.word_hashes(texts))
    assert [len(h) for h in got] == [len(t.split()) for t in texts] and got[0][1] == got[3][0] and got[4][1] == got[0][0]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near", "leaks", "mix"]
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == [*docs.columns, "source_size", "target", "taken"]
    rows = out.collect()
    known = {r.doc_id for r in docs.collect()}
    assert rows and {r.doc_id for r in rows} <= known and len({r.doc_id for r in rows}) == len(rows)
    assert all(r.n_chars == len(r.text) and 0 < r.taken <= 3 * len(r.text.split()) for r in rows)
