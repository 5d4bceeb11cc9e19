"""larder: keyed feature tables, lookups and model scoring as Spark DataFrame plans.

Sub-packages
------------
functions   pure ``Column -> Column`` helpers used by feature derivations
sources     schemas, typed file reads, table sinks, shared storage, JDBC publish
operators   feature derivations, feature tables (upsert), lookups, model preparation,
            evaluation, model bundles and batch scoring
plans       the registered queries over the driver tables and their SQL oracles
streaming   micro-batch adapter that feeds a stream into a feature-table upsert
client      ``FeatureClient``: the workflow verbs on one object
"""

from larder.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
