"""filingstrata: layered (bronze, silver, gold) processing of quarterly filings on PySpark.

Every public function takes and returns DataFrames, so calls compose into one Catalyst plan.
"""

from filingstrata.session import build_session

__all__ = ["build_session"]
