"""quotelake: order-book and market-metadata analytics as Spark DataFrame transforms."""
