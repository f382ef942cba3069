"""Named metrics over the star, and queries on them."""
