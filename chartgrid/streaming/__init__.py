from .hourly import HourlyPartials, stream_hourly_vitals

__all__ = ["HourlyPartials", "stream_hourly_vitals"]
