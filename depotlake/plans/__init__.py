"""Whole jobs: reports, views, table handling and the warehouse build."""
