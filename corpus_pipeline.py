"""The corpus pipeline; its stages are in ``folioflow.llm.pipeline``."""

from folioflow.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
