"""A training corpus from raw documents, stage by stage."""

from tallyfield.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
