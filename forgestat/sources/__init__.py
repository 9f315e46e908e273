"""Bronze layer: schemas, landing reads, adapters, cursors and write modes."""
