from tidemark.plans.measure_job import MeasureJob, delta_of, measure_delta, measured_rows

__all__ = ["MeasureJob", "delta_of", "measure_delta", "measured_rows"]
