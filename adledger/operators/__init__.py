"""Relational building blocks: snapshot picks, network steps, roll-ups."""
