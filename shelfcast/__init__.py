"""shelfcast: retail demand analytics as lazy Spark DataFrame plans."""
