"""Corpus preparation on Spark: shards, vocabularies, token streams, next-token statistics."""

from pyspark import cloudpickle

import lexmill

# Arrow functions and data sources travel inside the task, so executors need no
# copy of the package on their path.
cloudpickle.register_pickle_by_value(lexmill)
