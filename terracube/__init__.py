"""terracube: monthly gridded climate and vegetation cubes as Spark DataFrames.

A cube is a long DataFrame keyed by ``(lat, lon, time)`` with one double
column per variable.  Every operator is a plain ``DataFrame -> DataFrame``
function so pipelines compose with ``df.transform(...)`` and Catalyst sees
one lazy plan end to end.
"""

from terracube.session import get_spark, checkpoint_dir, cut_lineage

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage"]
