"""Result pages that keep arriving."""
