"""Engineering-data analytics on Spark: part files, revisions, bills of materials and supplier prices."""

from partledger.context import RunContext
from partledger.session import build_session, shared_dir

__all__ = ["RunContext", "build_session", "shared_dir"]
