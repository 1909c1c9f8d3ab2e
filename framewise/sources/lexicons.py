"""Word lists: stop words.

Stop words are Spark's own English list (181 words), kept here as plain
values so that no file of the Spark installation is needed.
The list is bounded by its definition, which is what makes broadcasting it safe
at any data size.  The word -> sentiment table is derived from labelled
documents (``operators.text.polarity``).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Spark's default English stop words, in its order.
_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()


def english_stop_words() -> tuple[str, ...]:
    """Spark's default English stop words (``StopWordsRemover`` list)."""
    return tuple(_STOP_WORDS)


def stop_words(spark: SparkSession) -> DataFrame:
    """The list as a local relation, whose size Spark knows (that of a parallelised
    list counts as unbounded, and a join with it moves the other side)."""
    schema = T.StructType([T.StructField("word", T.StringType(), False)])
    return spark.createDataFrame(pa.table({"word": list(english_stop_words())}), schema)
