"""The report's building blocks: list clean-up, category expansion, sales pulls."""
