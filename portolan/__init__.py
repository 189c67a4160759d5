"""Portolan: star-schema building blocks for arrival/departure records on Spark.

Every public function takes and returns Spark ``DataFrame``/``Column`` objects.
"""

__version__ = "0.1.0"
