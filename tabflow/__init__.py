"""tabflow: reusable, parameterised Spark DataFrame operators.

Every public operator is a pure ``DataFrame -> DataFrame`` function (or a
small helper returning a Spark ``Column``) so the same code serves batch jobs,
Structured Streaming queries and SQL views. The work always runs on Spark;
nothing is collected to the driver except bounded, already-aggregated results.
"""

from tabflow.session import get_session, shared_path

__all__ = ["get_session", "shared_path"]
