"""The layers: bronze, silver, gold, quality, reports and the staged run."""
