"""quarry: warehouse reports, text features and model jobs as Spark DataFrame plans.

Every operator takes DataFrames and returns a lazy DataFrame; the caller runs
the action. Sub-packages:

* ``sources``   - table loading, CSV / JSON / text / JDBC readers, views.
* ``functions`` - column expressions (tolerant casts, date parts, tokenisers).
* ``operators`` - relational, quality, text, feature, model and metric operators.
* ``plans``     - composed reports and jobs over the warehouse analog tables.
* ``streaming`` - the incremental (Structured Streaming) form of word count.
"""

from quarry.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
