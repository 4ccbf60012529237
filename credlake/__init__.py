"""credlake: loan-application analytics on Spark.

Bronze (raw JSON records) -> silver (one typed feature row per application)
-> gold (star schema) -> semantic view, with quality gates and an audit log.
Every stage is a DataFrame -> DataFrame function; storage and orchestration
live in ``credlake.sources.store`` and ``credlake.plans.run``.
"""

__version__ = "0.1.0"
