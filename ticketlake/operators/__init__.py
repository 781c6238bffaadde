from . import lookup, position, reshape, rules

__all__ = ["lookup", "position", "reshape", "rules"]
