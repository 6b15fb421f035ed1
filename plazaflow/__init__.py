"""Analytics for places that are part landlord and part operator, on Spark."""
