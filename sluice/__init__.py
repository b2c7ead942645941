"""sluice: broker-message pipelines as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a small named
tuple of frames for split outputs).  Nothing is collected to the driver;
ordered per-key state is computed with a blocked prefix scan so that a hot
key is spread over many tasks (see ``sluice.operators.scan``).
"""

from sluice.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
