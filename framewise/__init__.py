"""framewise: everyday table analytics as Spark DataFrame -> DataFrame functions.

Layout
------
sources/    readers, stand-in views, word lists, file round trips
functions/  Column-level expressions (text cleaning, binning, n-grams)
operators/  DataFrame -> DataFrame operators (profile, verbs, windows,
            text, statistics, models, graph search)
plans/      the registered query catalogue and its SQL oracle
"""

from framewise.session import get_spark, checkpoint_dir, scratch_path

__all__ = ["get_spark", "checkpoint_dir", "scratch_path"]
