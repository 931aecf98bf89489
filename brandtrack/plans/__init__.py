"""Report-level results: metrics, totals, trend and summary."""
