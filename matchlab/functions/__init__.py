"""Column expressions (JVM-side, no Python UDF)."""

from matchlab.functions.columns import *  # noqa: F401,F403
