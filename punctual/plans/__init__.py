"""Result views composed from the operators."""
