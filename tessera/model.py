"""The relations of the retrieval workbench as Spark schemas (DDL)."""

from __future__ import annotations

CONTENTS = (
    "content_id STRING, newsletter_id BIGINT, source_key STRING, content_date DATE, title STRING, author STRING, url STRING, content_md STRING,"
    " scrape_status STRING, fetch_tier STRING, fetch_attempts INT, vector_status STRING, stored_at TIMESTAMP_NTZ"
)
WORK_ITEM = "content_id STRING, title STRING, author STRING, url STRING, source_key STRING, content_date STRING, content_md STRING"
CHUNK = "text STRING, heading STRING, index INT"
CHUNK_RECORD = "content_id STRING, title STRING, author STRING, url STRING, source_key STRING, content_date STRING, chunks ARRAY<STRUCT<text: STRING, heading: STRING, index: INT>>"
METADATA = "title: STRING, author: STRING, content_date: STRING, url: STRING, content_id: STRING, chunk_index: INT, heading: STRING"
EMBEDDING_RECORD = (
    "content_id STRING, source_key STRING, metadata_base STRUCT<title: STRING, author: STRING, content_date: STRING, url: STRING>,"
    f" chunks ARRAY<STRUCT<id: STRING, document: STRING, embedding: ARRAY<FLOAT>, metadata: STRUCT<{METADATA}>>>"
)
COLLECTION = f"id STRING, content_id STRING, document STRING, embedding ARRAY<FLOAT>, metadata STRUCT<{METADATA}>"
QUERY = "query_id STRING, query STRING, expected ARRAY<STRING>, category STRING"
RESULT = f"query_id STRING, rank INT, chunk_id STRING, content_id STRING, document STRING, score DOUBLE, metadata STRUCT<{METADATA}>"
