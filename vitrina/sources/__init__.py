from vitrina.sources.readers import read_csv, read_jdbc, read_table, read_xml
from vitrina.sources.retail import Retail

__all__ = ["Retail", "read_csv", "read_jdbc", "read_table", "read_xml"]
