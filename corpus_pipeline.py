"""Raw documents to training sequences: quality, near-duplicates, decontamination, personal data, packing."""

from shotline.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
