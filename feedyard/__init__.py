"""feedyard: landing, adjudication and quality of file feeds as Spark DataFrame jobs."""
