"""Writers of scores, texts, ALTO pages and training files."""
