"""DataFrame-in, DataFrame-out operators. None of them triggers a Spark action unless it says so."""
