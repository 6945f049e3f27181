"""cohortlake: subscriber-churn analytics expressed as Spark DataFrame plans.

Every public operator takes and returns ``DataFrame`` objects (or ``Column``
expressions) and never builds its own ``SparkSession``.
"""

from cohortlake.config import CONFIG, PipelineConfig

__all__ = ["CONFIG", "PipelineConfig"]
