"""terrace: knowledge-base and corpus analytics as Spark DataFrame programs."""
