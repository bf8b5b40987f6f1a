"""PySpark-native engine for digitised historical telephone directories."""
