"""lavra: analytics over court-document corpora, expressed as Spark plans."""
