"""Input schemas, readers, writers and the shared work folder."""
