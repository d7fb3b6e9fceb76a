from .jobs import Endpoint, first_move_job, late_job, loader_job, moving_job, validation_job, zscore_job

__all__ = ["Endpoint", "first_move_job", "late_job", "loader_job", "moving_job", "validation_job", "zscore_job"]
