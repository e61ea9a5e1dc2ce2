"""Operators for training data of language models. Nothing else in the library imports this."""

from pyspark import cloudpickle

import prefdata

# Python workers get the functions themselves and need no copy of the package.
cloudpickle.register_pickle_by_value(prefdata)
