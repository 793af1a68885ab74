"""matchlab: match analytics on Spark DataFrames.

Every public function takes DataFrames and returns DataFrames; nothing is
collected to the driver except where a function documents it (the quality
gate, model fitting).
"""

from matchlab.config import FeatureConfig, NOTEBOOK, DAG

__all__ = ["FeatureConfig", "NOTEBOOK", "DAG"]
