"""tallyguard: forensic analytics over financial ledgers, as Spark DataFrame operators."""

__version__ = "0.1.0"
