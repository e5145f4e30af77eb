from terracube.streaming.monthly import monthly_first_stream, run_monthly_first

__all__ = ["monthly_first_stream", "run_monthly_first"]
