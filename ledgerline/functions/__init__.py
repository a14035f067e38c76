from . import core, rules

__all__ = ["core", "rules"]
