"""DataFrame operators: derivations, feature tables, lookups, preparation, models."""

from larder.operators.feature_table import (
    FeatureTable,
    check_keys,
    create_feature_table,
    drop_feature_table,
    feature_table_exists,
    get_feature_table,
    read_feature_table,
    save_features,
    write_feature_table,
)
from larder.operators.lookup import FeatureLookup, TrainingSet, attach_features, create_training_set
from larder.operators.skew import SkewPolicy
from larder.operators.transforms import demographic_features, prejoin, ticket_features

__all__ = [
    "FeatureLookup",
    "FeatureTable",
    "SkewPolicy",
    "TrainingSet",
    "attach_features",
    "check_keys",
    "create_feature_table",
    "create_training_set",
    "demographic_features",
    "drop_feature_table",
    "feature_table_exists",
    "get_feature_table",
    "prejoin",
    "read_feature_table",
    "save_features",
    "ticket_features",
    "write_feature_table",
]
