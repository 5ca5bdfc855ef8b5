from tickloom.functions import columns, text, times

__all__ = ["columns", "text", "times"]
