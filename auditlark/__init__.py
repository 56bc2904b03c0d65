"""Privacy-compliance auditing expressed as Spark DataFrame jobs."""

from auditlark.rulepack import DEFAULT_PACK, RulePack

__all__ = ["DEFAULT_PACK", "RulePack"]
