"""Column-level building blocks: everything here returns ``Column`` expressions."""
