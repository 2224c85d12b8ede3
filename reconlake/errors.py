"""What a failing query, job or connection raises. PySpark hands some of it on unconverted."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

ENGINE_ERRORS = (PySparkException, Py4JJavaError)
