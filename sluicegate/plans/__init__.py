"""Reports, quality figures and upkeep plans over cleaned tables."""
