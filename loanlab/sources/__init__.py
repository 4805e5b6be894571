from loanlab.sources.tables import (  # noqa: F401
    load_model, read_table, save_model, table, write_table,
)
