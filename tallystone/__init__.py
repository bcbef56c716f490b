"""Financial data quality, reporting and liquidity analytics as DataFrame-to-DataFrame operators."""

__version__ = "0.1.0"
