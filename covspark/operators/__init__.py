"""operators of covspark."""
