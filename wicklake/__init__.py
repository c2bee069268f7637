"""Candle (OHLCV) analytics as PySpark DataFrame jobs."""
