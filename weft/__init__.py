"""weft: Spark-native preparation and evaluation of instruction, chat,
preference and plain-text corpora.

Every operator is a DataFrame-in, DataFrame-out function built from Spark SQL
expressions (higher-order functions for per-row arrays), joins, windows and
aggregations.  Python runs only inside Arrow-batched pandas UDFs where the
built-ins cannot express a metric (ROUGE-L, BLEU) or where the user plugs in
their own tokenizer or predictor.
"""

from weft.session import get_session, checkpoint_dir, read_table  # noqa: F401

__version__ = "0.1.0"
