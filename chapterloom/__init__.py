"""chapterloom: Spark jobs for serialised translation corpora."""
