"""blockpulse: city event feeds, property sales and listing documents as Spark panels and series."""
