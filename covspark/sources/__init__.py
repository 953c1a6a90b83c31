"""sources of covspark."""
