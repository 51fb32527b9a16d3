"""Post-training data preparation, grading and run comparison on Spark DataFrames."""
