"""Insurance analytics on Spark: claims, policies, clients and payments as DataFrame operators."""
