"""Reading and writing tables: files, feeds, snapshots, logs."""
