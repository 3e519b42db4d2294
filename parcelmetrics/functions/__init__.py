"""Column expressions: money, fee rates, weights, carriers, labels."""
