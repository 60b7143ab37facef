"""Feature families: compositions of the operators, one lazy plan per family."""
