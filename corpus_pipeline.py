"""A training-data pipeline in five stages, each by one of the corpus operators.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. Each stage's result
is written as Parquet to the folder that driver and executors share and read again as the next one's input, so a lost
executor costs one stage's tasks at most.
"""

from chartsift.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
