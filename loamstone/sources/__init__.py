"""Sources: Parquet tables, JSONL trees and the shared work folder."""
