"""reelmart: film and television catalogue analytics on Spark DataFrames.

Layers, each a module of lazy DataFrame functions:

* ``reelmart.sources``   landing-file dialect, raw catalogue, load and audit
* ``reelmart.operators`` staging views, marts, skew-safe key joins, data-quality checks
* ``reelmart.plans``     the analytical questions, dashboard datasets, build / store / run
* ``reelmart.streaming`` exactly-once incremental append of landing files
* ``reelmart.functions`` column-expression helpers (built-in functions only)
"""

from reelmart.plans.pipeline import Warehouse, build, materialize, run  # noqa: F401
from reelmart.session import get_session  # noqa: F401

__version__ = "0.1.0"
__all__ = ["Warehouse", "build", "materialize", "run", "get_session", "__version__"]
