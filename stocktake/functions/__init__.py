"""Column -> Column cleaning expressions, all JVM-side."""
