"""The default stop list: Spark ML's English list. Every operator takes a list of its own instead."""

from __future__ import annotations

import functools
import glob
import os
import zipfile

import pyspark


@functools.lru_cache(maxsize=1)
def default_stop_words() -> tuple[str, ...]:
    from pyspark import SparkContext

    if SparkContext._active_spark_context is not None:
        from pyspark.ml.feature import StopWordsRemover

        return tuple(StopWordsRemover.loadDefaultStopWords("english"))
    # No session yet (the list is only wanted as text): read the file that Spark ships.
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    jar = glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar"))[0]
    with zipfile.ZipFile(jar) as z:
        return tuple(z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split("\n"))
