"""Loading only what is new."""

from ledgerline.streaming.latest import keep_latest
from ledgerline.streaming.new_files import load_new_documents, load_new_files

__all__ = ["keep_latest", "load_new_documents", "load_new_files"]
