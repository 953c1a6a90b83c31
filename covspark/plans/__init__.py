"""plans of covspark."""
