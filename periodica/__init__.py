"""Company fundamentals and market data on Spark.

The package lands regulatory documents, price and currency series and index
membership as DataFrames, derives yearly financials from them and answers
point-in-time questions. Every job is a DataFrame plan; see README.md.
"""

from periodica.session import build_session

__all__ = ["build_session"]
