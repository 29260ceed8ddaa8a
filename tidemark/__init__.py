"""tidemark: lakehouse operators for PySpark, from raw text loads to rated marts."""
