"""Sources and sinks: behaviour log, text corpora, inline rows, writers."""

from basketry.sources.behaviour import (
    behaviour_from_events,
    load_behaviour,
    read_behaviour_csv,
    read_behaviour_table,
    rejected_rows,
    typed_behaviour,
    write_behaviour_csv,
    write_behaviour_table,
)
from basketry.sources.inline import behaviour_names
from basketry.sources.sinks import json_series, preview, write_csv
from basketry.sources.text import labelled_corpus, load_corpus, read_text_lines, two_file_corpus, write_text_lines

__all__ = [
    "behaviour_from_events",
    "behaviour_names",
    "json_series",
    "labelled_corpus",
    "load_behaviour",
    "load_corpus",
    "preview",
    "read_behaviour_csv",
    "read_behaviour_table",
    "read_text_lines",
    "rejected_rows",
    "two_file_corpus",
    "typed_behaviour",
    "write_behaviour_csv",
    "write_behaviour_table",
    "write_csv",
    "write_text_lines",
]
