"""gridlake: device telemetry normalisation on Spark.

Payload text -> VARIANT (parsed once) -> first row per request id -> source
detection -> registry rules as column expressions -> canonical readings and
rejects, with the read, lifecycle, registry and streaming operators around it.
See README.md for the layout and the scale design.
"""

__version__ = "0.1.0"
