from terracube.sources.tables import read_table
from terracube.sources.grid import monthly_grid, load_grid, daily_series

__all__ = ["read_table", "monthly_grid", "load_grid", "daily_series"]
