"""panelmerge: multi-source (entity, period) panels on Spark.

Everything is DataFrame in, DataFrame out, built from Spark built-ins.
"""

from panelmerge.spec import PanelSpec, SourceSpec

__all__ = ["PanelSpec", "SourceSpec"]
__version__ = "0.1.0"
