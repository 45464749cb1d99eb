"""auditlens: security detections over an audit log, as Spark DataFrame operators.

Layers (each a ``DataFrame -> DataFrame`` function):

* ``operators.detections``  D1-D8 typed detections
* ``operators.summaries``   A1-A9 per actor / entity summaries over a look-back
* ``operators.assess``      R-* risk assessments (``functions.scoring`` scorers)
* ``operators.posture``     C1-C3 consolidation and posture
* ``operators.reports``     Q1-Q18 report queries
* ``operators.alerts``      L1-L10 alerts as data
* ``streaming``             ST1 detections on a stream, ST2 windowed threshold
* ``plans.pipeline``        ``SecurityPipeline``: every layer, one shared audit pass, snapshots
"""

from auditlens.plans.pipeline import SecurityPipeline
from auditlens.session import configure

__all__ = ["SecurityPipeline", "configure"]
