from dimweave.sources.tables import KEYS, SCHEMAS, Tables, load, table_path

__all__ = ["KEYS", "SCHEMAS", "Tables", "load", "table_path"]
