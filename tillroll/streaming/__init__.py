"""Sources that grow, and results that follow them."""
