"""Reading envelopes, embedded JSON rows and staged files."""
