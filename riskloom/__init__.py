"""riskloom: rule-based transaction risk scoring as Spark DataFrame plans."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions this package hands to Python workers (mapInArrow / mapInPandas,
# stateful streaming) are pickled by value, so executors need no copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .config import (DEFAULT_EXEC, DIALECT_HISTORY, DIALECT_WINDOW, EVENTS_RULES,  # noqa: E402,F401
                     SKEWPROOF_EXEC, ExecConfig, RuleConfig, parse_mcc_list)
from .operators.scoring import hits_long, score, scored_table, with_hits  # noqa: E402,F401
from .sources import (read_transactions_csv, read_transactions_strict,  # noqa: E402,F401
                      read_transactions_upload, write_nested, write_scored)
from .streaming import stream_scores, stream_window_scores  # noqa: E402,F401

__version__ = "0.1.0"
