"""pulseloom: social-community analytics as PySpark DataFrame operators."""
