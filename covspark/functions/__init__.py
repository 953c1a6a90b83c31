"""functions of covspark."""
