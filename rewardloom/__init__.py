"""rewardloom — human-feedback data jobs expressed as Spark DataFrame plans.

Every public operator is a pure function ``DataFrame -> DataFrame`` (plus
parameters); nothing is collected to the driver and nothing depends on
physical row order.  See README.md for the operator map.
"""

from rewardloom.config import Settings, DEFAULT_SETTINGS

__all__ = ["Settings", "DEFAULT_SETTINGS"]
