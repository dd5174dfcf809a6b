"""Relational operators of the engine: keys, registry, generation, transformation, verification."""
