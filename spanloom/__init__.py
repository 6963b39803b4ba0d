"""PySpark-native analytics over genomic intervals, sequences and alignments."""
