"""auditlens package."""
