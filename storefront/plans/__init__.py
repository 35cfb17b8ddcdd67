"""Query plans of the three analyses, and the registry of all of them."""
