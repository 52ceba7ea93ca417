from aurum.sources import schemas  # noqa: F401
from aurum.sources.readers import (  # noqa: F401
    explode_payload, flatten_struct, read_csv_table, read_json_lines, read_live_documents, read_root_array,
)
