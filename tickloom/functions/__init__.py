from .time import as_micros, floor_micros, from_micros, parse_time, whole_seconds

__all__ = ["as_micros", "floor_micros", "from_micros", "parse_time", "whole_seconds"]
