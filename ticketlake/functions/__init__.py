from . import dates, nulls, numbers, text

__all__ = ["dates", "nulls", "numbers", "text"]
