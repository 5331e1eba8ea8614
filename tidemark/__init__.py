"""tidemark: change capture, slowly changing dimensions and star schemas on Spark."""
