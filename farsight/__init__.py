"""farsight: k-center clustering, grid distance outliers and frequent-item
analytics expressed as Spark DataFrame plans.

Sub-packages:

* ``sources``    table / file readers and the point and item views
* ``functions``  column expressions (distances, grid cells, hash draws, parameters)
* ``operators``  the operators (grid outliers, farthest-first k-center, items)
* ``plans``      composed pipelines and the registered query catalog
* ``streaming``  Structured Streaming forms of the item operators
"""

__version__ = "0.1.0"
