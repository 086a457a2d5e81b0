"""Configuration, status rules and the three ladders built from the operators."""
