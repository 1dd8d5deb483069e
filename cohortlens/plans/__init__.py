"""Query registry (the reference's questions on the driver tables) and plan checks."""
