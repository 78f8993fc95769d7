"""Column functions (``Column -> Column``) built only from Spark built-ins."""
