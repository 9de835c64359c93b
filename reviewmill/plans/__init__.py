"""Plan-shaping helpers shared by the operators, and the end-to-end flows."""
