"""voxlode: mining needs out of user feedback with Spark DataFrames."""
