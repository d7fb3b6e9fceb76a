from .messages import decode, explode_stats, explode_zscores, read_messages, ticks_from

__all__ = ["decode", "explode_stats", "explode_zscores", "read_messages", "ticks_from"]
