"""How a batch of changes is cut into steps that keep the source's order."""
