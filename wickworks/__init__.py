"""Spark-native market-candle analytics: validated scans, candles, gap-aware segments and 128 causal features."""
