"""Rules, split, metrics, summaries and governance as DataFrame operators."""
