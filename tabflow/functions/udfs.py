"""The same upper-case transform three ways: native, row UDF, pandas UDF.

Native ``F.upper`` is the one to use (JVM-side, codegen). The UDF variants
exist to compare cost; both are null-safe.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship these functions by value: Python workers (on any executor) then need
# no installed copy of this package to run them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.udf(returnType=T.StringType())
def upper_udf(s):
    return None if s is None else s.upper()


@F.pandas_udf(T.StringType())
def upper_pandas(s: pd.Series) -> pd.Series:
    return s.str.upper()
