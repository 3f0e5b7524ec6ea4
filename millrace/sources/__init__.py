"""Reading and writing: feeds, topics, strict appends, published snapshots, quarantine."""
